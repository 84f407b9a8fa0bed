"""Registered queries on the driver's tables, each with the DuckDB SQL it must agree with."""
