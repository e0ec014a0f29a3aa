"""Operators for large text corpora. Nothing else in the library imports this subpackage."""

from shelfcast.functions.shipping import ship_by_value

ship_by_value(__name__)
