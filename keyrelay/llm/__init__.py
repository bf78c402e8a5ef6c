"""Training-data operators: ten corpus operators and their queries (``queries.py``); nothing outside uses them."""
