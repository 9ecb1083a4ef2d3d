"""The movie catalogue: one configuration of the operators, and the order its layers are built in."""
