"""Relational operators shared by the table builders."""
