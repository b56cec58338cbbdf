"""Reading tables, look-back windows, landed JSON files and page responses."""
