"""docmeter: document-quality analytics on PySpark DataFrames."""
