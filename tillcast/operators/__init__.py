"""DataFrame operators: cleaning, periods, quality, features, metrics, diagnostics."""
