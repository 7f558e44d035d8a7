"""DataFrame -> DataFrame operators; each takes its columns, keys and domains as arguments."""
