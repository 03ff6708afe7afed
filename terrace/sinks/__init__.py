"""Writers: tables with properties, external copies, layer namespaces."""
