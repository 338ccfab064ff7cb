"""Training-data operators: thirteen text operators, their queries and SQL.

Nothing else in ``centrix`` imports this subpackage.  Every operator takes
DataFrames and column names, returns DataFrames, and keeps the conventions
below unless its docstring says otherwise:

* a null text counts as the empty text; a null key is a key of its own;
* columns an operator adds replace input columns of the same name only in its
  own result (inputs are projected to the columns an operator needs, so extra
  columns with clashing names are never read);
* an empty table gives an empty result with the same schema;
* repeated rows are kept, each with its own result row.
"""
