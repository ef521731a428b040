"""Training-data operators on documents and pages. Nothing else in the library imports this package."""
