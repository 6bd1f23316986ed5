"""Composed jobs and the registry of queries exposed to the driver."""

from . import registry  # noqa: F401
from . import q_snapshots  # noqa: F401
from . import q_lookup_runs  # noqa: F401
from . import q_history  # noqa: F401
from . import q_rollups  # noqa: F401
from . import q_calendar  # noqa: F401
from . import q_crm  # noqa: F401
from . import q_matching  # noqa: F401
from . import q_movement  # noqa: F401
from . import q_text  # noqa: F401
from . import q_model  # noqa: F401
from . import q_io  # noqa: F401
from . import q_lifecycle  # noqa: F401
from . import q_dated  # noqa: F401
from . import q_jobs  # noqa: F401
from . import feature_jobs  # noqa: F401
from . import q_dictionary  # noqa: F401
from . import q_reconcile  # noqa: F401
