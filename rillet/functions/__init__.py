from rillet.functions.text import (asset_url, java_split, java_string_hash, poly_hash,
                                   register_sql_functions, scaled_hash_code)
from rillet.functions.udfs import avg_temp, split_pieces

__all__ = ["asset_url", "java_split", "java_string_hash", "poly_hash",
           "register_sql_functions", "scaled_hash_code", "avg_temp", "split_pieces"]
