"""The user-level jobs. Business literals are keyword arguments."""
