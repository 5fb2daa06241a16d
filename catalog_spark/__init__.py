"""DataFrame operators for course-catalogue data: flattening, latest versions, discovery, backlogs, events and outboxes."""
