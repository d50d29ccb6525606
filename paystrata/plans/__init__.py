"""SQL views and the queries registered for the driver."""
