"""Change operators: append, update, delete, merge and the checks around them."""
