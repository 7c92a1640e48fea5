"""Spark engine for collections of public policy documents."""
