from bayline.functions.scalars import (  # noqa: F401
    calendar_attributes,
    date_key,
    email_hash,
    in_domain,
    last4,
    month_boundaries,
    month_start,
    money,
    normalized_email,
    parse_date,
    present,
    ratio,
    share_pct,
    year_boundaries,
)
