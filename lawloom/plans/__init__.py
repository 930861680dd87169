"""Queries over the star-schema tables that exercise the operators, and the workflows of the register."""
