"""sparkloom: text analytics on Spark DataFrames."""
