"""Balancing-reserve analytics as Spark DataFrame operators.

Tables stay in long form (one row per time and product).  Every operator takes
and returns DataFrames and is lazy unless its docstring says otherwise.
"""
