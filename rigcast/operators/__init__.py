"""DataFrame operators (``DataFrame -> DataFrame``), grouped by concern."""
