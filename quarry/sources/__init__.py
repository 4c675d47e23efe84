"""Sources and sinks: driver tables, corpus files, signal / relevance / ranked text files."""
