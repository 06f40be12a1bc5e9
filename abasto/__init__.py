"""Inventory and purchasing analytics as Spark plans."""
