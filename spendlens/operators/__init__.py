"""DataFrame -> DataFrame operators of the attribution job."""
