"""Writers: page table, site links, series, archives, link lists, JSON."""
