from .quality import (
    date_like,
    drop_noise,
    error_summary,
    not_blank,
    not_like,
    numeric,
    quarantine,
    quarantine_files,
    required,
    split_stored,
    split_valid,
    tag_failures,
    us_date,
    with_defaults,
)
from .dedup import (
    distinct_rows,
    drop_key_duplicates,
    keep_latest,
)
from .cdc import (
    change_counts,
    classify_changes,
    delta,
    row_fingerprint,
    upsert,
)
from .shape import (
    expand_roles,
    explode_list,
    list_fits,
    unpivot_measures,
)
from .conforming import (
    Lookup,
    active_bridge,
    bridge_lookup,
    conform,
    enrich,
    flag_present,
    project,
    rename,
    role_lookup,
    sales_measures,
    special_members,
    spread,
    split_sensitive,
    union_sources,
    with_constants,
    with_special_members,
)
from .goals import (
    allocate_goals,
)
from .hierarchy import (
    LevelSource,
    hierarchy_id,
    level_hierarchy,
    manager_hierarchy,
    with_hierarchy_id,
)

__all__ = [n for n in dir() if not n.startswith("_")]
