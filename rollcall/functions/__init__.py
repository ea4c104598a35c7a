from rollcall.functions.text import (  # noqa: F401
    ACT_NOOP,
    ACT_REMOVE,
    ACT_VALIDATE,
    action_class,
    email_local_part,
    fold,
    fold_name,
    in_zone,
    norm_email,
    norm_id,
    norm_id_of,
    norm_local,
    strip,
    strip_leading_zeros,
    text,
    valid_email,
    valid_email_predicate,
)
