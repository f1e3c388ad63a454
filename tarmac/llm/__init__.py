"""Operators for large text collections and the queries that apply them; nothing else imports this."""
