"""Scalar ``Column -> Column`` functions used by every operator."""

from slotbook.functions.text import (  # noqa: F401
    blank_to_zero, decimal_or_null, first_element, java_long, jtrim, part,
    quote_regex, split_fixed, split_keep, url_domain,
)
from slotbook.functions.time import (  # noqa: F401
    bounds_from_label, format_ts, hour_label, label_to_slot_ms, local_ms,
    ms_to_ntz, pad_ms, slot_end_text, slot_index, slot_label, slot_start_ms,
    slot_start_text,
)
