"""Table operators: `DataFrame -> DataFrame`, made for `df.transform`."""
