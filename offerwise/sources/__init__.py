"""Tables in, tables out: schemas, readers, sinks and staged intermediate tables."""
