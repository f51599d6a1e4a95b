"""How work is laid out over the cluster, and the complete forecast run."""
