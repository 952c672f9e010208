"""Writers of warehouse tables."""
