"""The plant's specs, the layer builders and jobs, and the registered queries."""
