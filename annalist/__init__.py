"""annalist: an evidence-history engine expressed in Spark SQL and DataFrames."""
