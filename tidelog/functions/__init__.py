"""Column functions: converters of database types to the event schema's types."""
