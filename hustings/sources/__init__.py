"""Landed inputs to tables, tables to published outputs."""
