"""Sources and sinks: shared tables, text/JSON/CSV/libsvm files, views and tables."""
