"""DataFrame operators: lists, identity, membership, orders, wecom."""
