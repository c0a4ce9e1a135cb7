"""DataFrame operators: shape, load, reconcile, audit, report."""
