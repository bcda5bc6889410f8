"""DataFrame operators: latest version, rule sets, keyed upsert, surrogate keys, checks."""
