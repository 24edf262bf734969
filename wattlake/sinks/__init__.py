"""Writers: events, tables, reports."""
