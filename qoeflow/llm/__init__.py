"""Training-data operators: ten operators over documents and pages, and their registered queries."""
