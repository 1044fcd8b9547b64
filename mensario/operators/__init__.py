"""DataFrame to DataFrame steps; none of them triggers a job unless its docstring says so."""
