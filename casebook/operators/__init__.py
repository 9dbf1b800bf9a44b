"""Relational steps. Each takes DataFrames and returns one, lazily.

Two shapes recur, chosen so that one key may hold a large share of all rows:

* One row per key is taken with ``row_number() == 1``. Spark cuts each map task's output to one row
  per key before the shuffle (``WindowGroupLimit``), so a hot key arrives as one row per task.
* All rows at a key's best value are taken with an aggregate (combined map-side) and a semi-join on
  key and value. No window ever gathers a key; the join's hot partitions are split at run time.
"""
