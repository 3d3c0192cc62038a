from lakewright.functions.base58 import b58encode, b58encode_checked
from lakewright.functions.epoch import epoch_day, from_epoch_millis
from lakewright.functions.paths import path_or_null
from lakewright.functions.registry import register_functions

__all__ = ["b58encode", "b58encode_checked", "epoch_day", "from_epoch_millis", "path_or_null", "register_functions"]
