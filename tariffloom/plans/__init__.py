"""Runnable queries: one callable per operator, each over whole tables."""
