"""DataFrame operators: messages, normalisation, routing, collection."""
