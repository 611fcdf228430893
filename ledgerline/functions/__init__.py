from ledgerline.functions.columns import (  # noqa: F401
    MONEY, actor_type, as_ntz, event_clock, flag, grain_key, tokenise, try_int, try_money,
)
from ledgerline.functions.contract import REASONS, classify, default_rules  # noqa: F401
from ledgerline.functions.masking import mask_account, mask_columns, register_sql_mask  # noqa: F401
from ledgerline.functions.zorder import zorder_key  # noqa: F401
