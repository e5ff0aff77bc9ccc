"""Training-data operators over document and vector tables. Nothing else in the library imports this subpackage."""
