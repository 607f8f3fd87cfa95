"""flowlens: network-intrusion analytics on PySpark DataFrames."""
