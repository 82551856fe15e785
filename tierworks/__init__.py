"""tierworks: Bronze / Silver / Gold analytics on Spark DataFrames.

Every operator takes DataFrames and returns a DataFrame (or a Column), never
looks at the clock, and leaves physical planning to Catalyst.  Operators that
work on ordered groups (``operators.sequences``) or on exact quantiles
(``operators.quantiles``) split large groups, so one busy key does not end up
in one task.
"""
