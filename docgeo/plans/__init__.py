"""End-to-end plans (workflow entry points), derived fixture tables and the named query registry."""
