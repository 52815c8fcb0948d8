"""Writers: append tables, keyed tables, refreshed views and storage layout."""
