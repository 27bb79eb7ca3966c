"""Training-data operators at corpus scale; nothing else in the package imports them."""
