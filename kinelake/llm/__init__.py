"""Operators for language-model and policy training data; nothing else imports this package."""
