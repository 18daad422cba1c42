"""Operators for building training data from document tables; nothing else imports them."""
