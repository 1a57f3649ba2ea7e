"""Named plans: each operator bound to the provided tables, with its SQL twin."""
