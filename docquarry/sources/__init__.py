"""Where rows come from and go to."""
