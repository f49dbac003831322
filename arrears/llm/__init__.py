"""Training-data operators: each module holds one operator, ``queries`` applies them."""
