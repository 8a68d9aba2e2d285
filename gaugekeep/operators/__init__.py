"""DataFrame -> DataFrame operators: daily means, key-based merges, station
selection and run reports."""
