"""Training-data operators. Nothing outside this folder imports it; it may be deleted as a whole."""
