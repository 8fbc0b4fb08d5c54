"""Writers: layers, published tables with a manifest, warehouse tables."""
