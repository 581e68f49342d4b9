"""SQL expression texts over built-in functions.

Functions take and give SQL text, so whole projections reach Spark as a few
`selectExpr` calls and run as plain Catalyst expressions.
"""
