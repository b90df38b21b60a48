"""Training-data operators; each module registers its query in ``QUERIES`` (and ``ORACLES``)."""
