"""DataFrame operators: schema, unions, keys, series, calendars, quarters, quality."""
