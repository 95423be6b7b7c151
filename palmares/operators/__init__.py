"""DataFrame operators: schema, filters, rules, lookups, derivations, aggregates, quality."""
