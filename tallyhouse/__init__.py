"""Tallyhouse: payment-transaction cleaning, masking and merchant analytics on Spark."""
