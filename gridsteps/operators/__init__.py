"""Composable DataFrame operators on cell/band/year tables."""
