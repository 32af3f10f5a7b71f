"""DataFrame -> DataFrame operators (the ones that shuffle or take actions)."""
