"""Column expressions (F1-F11) and SQL function registration."""

from centrix.functions.numeric import (millis, n_local_trials, per_cluster_rows,
                                       round_to, trunc_to_long)
from centrix.functions.hashrand import (hash_uniform, hash_uniform_sql, np_hash_uniform,
                                      normal_sql, stream)
from centrix.functions.text import (dataset_name, parse_json_array, split_ws, to_numbers)
from centrix.functions.vector import (register_sql_functions, sq_dist, sq_norm,
                                      vec_add, vec_div, vec_least)

__all__ = [
    "sq_dist", "sq_norm", "vec_add", "vec_div", "vec_least", "register_sql_functions",
    "split_ws", "to_numbers", "parse_json_array", "dataset_name",
    "trunc_to_long", "millis", "round_to", "n_local_trials", "per_cluster_rows",
    "stream", "hash_uniform", "hash_uniform_sql", "np_hash_uniform", "normal_sql",
]
