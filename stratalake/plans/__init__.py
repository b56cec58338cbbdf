"""Jobs: load raw rows, refresh cleaned tables, refresh the star schema, run all of it."""
