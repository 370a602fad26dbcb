"""Writers of layer tables, quarantined rows and reports."""
