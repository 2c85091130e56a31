"""DataFrame-to-DataFrame operators; each works with ``df.transform``."""
