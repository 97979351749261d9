"""DataFrame operators: each takes DataFrames (plus column names / parameters) and
returns a lazily planned DataFrame. No collects, no Python UDFs; the one that runs a job at once is
``ordered.sequential_number`` (and what numbers events with it), which counts rows by ranges first and writes
them only where one column does not part them."""
