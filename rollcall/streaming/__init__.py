"""The batch transforms over files as they land."""
