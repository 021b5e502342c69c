"""Document similarity at scale, as DataFrame-to-DataFrame operators on PySpark."""
