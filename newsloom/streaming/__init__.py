"""The bronze load fed by a file stream of landed pages."""
