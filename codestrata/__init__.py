"""Facts about many source repositories as Spark tables."""

from codestrata.plans.collection import (  # noqa: F401
    Collection,
    collect_snapshots,
    full_collection,
    incremental_collection,
)
from codestrata.session import configure  # noqa: F401
