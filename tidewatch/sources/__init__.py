"""Where rows come from: the wire, the raw events table, stored metric tables."""
