"""DataFrame operators the plans are put together from."""
