"""The supplied test tables seen as a rail network, and the same in DuckDB SQL."""
