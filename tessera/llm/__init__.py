"""Operators for large-scale language-model training data; nothing else in the library imports them."""
