"""The billing reports and feeds, each one function from tables to a frame or a Result."""
