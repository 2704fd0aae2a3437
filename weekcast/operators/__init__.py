"""DataFrame operators of the promotion and forecast jobs."""
