"""paperloom: document-record analytics expressed as Spark DataFrame plans."""
