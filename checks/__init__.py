"""The operators on the test tables: input views, named queries and their SQL counterparts."""
