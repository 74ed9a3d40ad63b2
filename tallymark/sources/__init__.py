"""Reading tables and file catalogues, writing result tables and fitted state."""
