"""Writers: columnar tables, partitioned and bucketed layouts, tab-separated text."""
