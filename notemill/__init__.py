"""Chart features on Spark: table-in, table-out DataFrame operators.

Sub-packages: ``functions`` (column expressions), ``operators`` (DataFrame to
DataFrame), ``sources`` (landed files, tables, views derived from the test
tables) and ``plans`` (table refreshes and the registered queries).
"""
