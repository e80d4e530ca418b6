"""Column-to-column functions; everything here stays inside Catalyst."""

from statlake.functions.casts import (
    guarded_date,
    parse_count,
    parse_date,
    parse_decimal,
    parse_int,
    parse_long,
    parse_money,
)
from statlake.functions.codes import code_map, flag_or_false, yes_no
from statlake.functions.keys import joined_md5, surrogate_key
from statlake.functions.metrics import (
    absolute_gap,
    extra_base_hits,
    half_sum,
    on_base_percentage,
    outs_made,
    outs_to_innings,
    pitching_rates,
    plate_appearances,
    round_half_away,
    safe_divide,
    times_on_base,
    total_bases,
)
from statlake.functions.text import (
    display_value,
    link_id_type,
    link_note,
    link_player_id,
    link_team_id,
    null_texts,
    strip_accents,
)

__all__ = [name for name in dir() if not name.startswith("_")]
