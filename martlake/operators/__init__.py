"""DataFrame operators (``DataFrame -> DataFrame``)."""
