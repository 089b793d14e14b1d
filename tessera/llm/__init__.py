"""Training-data operators (documents, pages, conversations) and their checked queries."""
