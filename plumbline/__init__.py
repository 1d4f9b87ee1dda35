"""Plumbline: controlled data loads on Spark.

Landed files are fingerprinted, registered, reshaped to long staging rows,
checked by named quality rules, classified against a keyed master, upserted,
reconciled and reported.  Every operator takes DataFrames and returns
DataFrames; keys, value columns, rules and formats are arguments.
"""
