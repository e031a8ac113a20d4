"""DataFrame operators; each is used with ``df.transform(...)``."""
