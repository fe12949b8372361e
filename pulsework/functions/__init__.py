from pulsework.functions.channels import CHANNEL_METRICS, channel_measure, message_fields
from pulsework.functions.coerce import (
    bool_or_false,
    bool_unless_false_text,
    double_or_zero,
    falsy_json_to_null,
    int_or_zero,
    json_path,
    json_size,
)
from pulsework.functions.text import (
    comma_list,
    distinct_comma_list,
    is_control_name,
    tag_value,
)
from pulsework.functions.times import (
    day_text,
    days_before,
    epoch_zero_to_null,
    from_epoch_seconds,
    greatest_time,
    in_days,
    least_time,
    not_in_days,
    parse_iso,
    parse_second_text,
    skew_corrected_time,
    to_epoch_seconds,
)
