MODULES = ("bars_queries", "join_queries", "event_queries", "screens", "table_queries", "stream_queries", "block_queries")
