"""Registered queries (``catalog``) and their DuckDB SQL oracles (``oracle``)."""
