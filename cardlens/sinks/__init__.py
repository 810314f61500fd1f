"""Writers: keyed tables, plain files, messages and reports."""
