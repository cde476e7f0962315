from variantlake.functions.domains import (  # noqa: F401
    FUNNEL_ORDER,
    PARTITION_COLUMNS,
    USER_KEY,
    VALID_BEHAVIOR_EVENTS,
    VALID_VARIANTS,
)
from variantlake.functions.expressions import (  # noqa: F401
    behavior_is_valid,
    exposure_is_valid,
    funnel_order,
    parse_event_time,
    pct,
)
