"""Plans: whole collections in, the four linked tables out."""
