"""DataFrame -> DataFrame operators of the staging, intermediate and mart layers."""
