"""Reading a workspace: file inventory, CSV rows, catalog, registry, snapshot and change log."""
