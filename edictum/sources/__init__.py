"""Readers and writers for the tables and files the engine works on."""
